"""Accounting of cells and rows: which were read, which a rule explains, which stay open; hidden spans; missing periods."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T


def rule_matches(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """Every rule whose rectangle holds a cell. Rules are a register of a few hundred rows: broadcast."""
    r = rules.select("rule_id", F.col("source_sheet").alias("rule_sheet"), "row_from", "row_to", "column_from", "column_to", "classification")
    inside = F.col("row_id").between(F.col("row_from"), F.col("row_to")) & F.col("column_id").between(F.col("column_from"), F.col("column_to"))
    return cells.join(F.broadcast(r), ((F.col("rule_sheet") == F.col("source_sheet")) | (F.col("rule_sheet") == "*")) & inside)


def unmapped(cells: DataFrame, observations: DataFrame) -> DataFrame:
    """Cells with a number that no observation read."""
    used = observations.select("source_sheet", F.col("source_row").alias("row_id"), F.col("source_column").alias("column_id"))
    return cells.filter("num is not null").join(used, ["source_sheet", "row_id", "column_id"], "left_anti")


def classified(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """The exact sheet beats the wildcard, then the smaller rectangle, then the rule's id.

    A sheet's rules travel as one array in that order (a register of a few hundred rows: broadcast), of which a cell takes the
    first that holds it: no shuffle of cells.
    """
    area = ((F.col("row_to") - F.col("row_from") + 1) * (F.col("column_to") - F.col("column_from") + 1)).alias("area")
    listed = F.sort_array(F.collect_list(F.struct(area, "rule_id", "row_from", "row_to", "column_from", "column_to", "classification")))
    own = rules.filter("source_sheet <> '*'").groupBy("source_sheet").agg(listed.alias("_own"))
    every = rules.filter("source_sheet = '*'").agg(listed.alias("_every"))  # one row
    inside = lambda r: F.col("row_id").between(r["row_from"], r["row_to"]) & F.col("column_id").between(r["column_from"], r["column_to"])
    joined = cells.join(F.broadcast(own), "source_sheet", "left").crossJoin(F.broadcast(every))
    first = F.coalesce(F.try_element_at(F.filter("_own", inside), F.lit(1)), F.try_element_at(F.filter("_every", inside), F.lit(1)))
    return joined.withColumn("_b", first).select("source_sheet", "row_id", "column_id", F.col("_b.rule_id").alias("rule_id"), F.coalesce("_b.classification", F.lit("unclassified")).alias("classification"))


def reconciliation(cells: DataFrame, observations: DataFrame, rules: DataFrame) -> DataFrame:
    """One row for each sheet, offered = accepted + explained + open, and its status."""
    offered = cells.groupBy("source_sheet").agg(F.count("num").alias("offered"), F.count_if(F.col("tok") == "s/m").alias("tokens"), F.count_if(F.col("tok") == "").alias("blanks"))
    accepted = observations.groupBy("source_sheet").agg(F.count("*").alias("accepted"))
    sorted_out = classified(unmapped(cells, observations), rules).groupBy("source_sheet").agg(
        F.count_if(F.col("classification") != "unclassified").alias("explained"), F.count_if(F.col("classification") == "unclassified").alias("open"), F.count_if(F.col("classification") == "parser_defect").alias("defects")
    )
    joined = offered.join(accepted, "source_sheet", "left").join(sorted_out, "source_sheet", "left").na.fill(0)
    return joined.withColumn("status", F.when(F.col("open") > 0, "unreconciled").when(F.col("defects") > 0, "defective").otherwise("reconciled"))


def unused_rules(cells: DataFrame, rules: DataFrame) -> DataFrame:
    """Rules that matched nothing."""
    return rules.join(rule_matches(cells, rules).select("rule_id").distinct(), "rule_id", "left_anti").select("rule_id")


def wildcard_join(rows: DataFrame, register: DataFrame, key: str, columns: list[str], sheet: str = "source_sheet") -> DataFrame:
    """One register row for each row: that of the exact sheet, else that of '*'."""
    value = F.struct(*columns)
    exact = register.filter(F.col(sheet) != "*").select(key, sheet, value.alias("_exact"))
    any_sheet = register.filter(F.col(sheet) == "*").select(key, value.alias("_any"))
    joined = rows.join(F.broadcast(exact), [key, sheet], "left").join(F.broadcast(any_sheet), key, "left")
    return joined.withColumn("_one", F.coalesce("_exact", "_any")).select(*rows.columns, *(F.col(f"_one.{c}").alias(c) for c in columns))


def spans(packed: DataFrame, column: str) -> DataFrame:
    """G19: 'a-b;c' lists as rows (lo, hi)."""
    each = F.explode(F.split(column, ";")).alias("_s")
    return packed.select(*[c for c in packed.columns if c != column], each).select("*", F.split_part("_s", F.lit("-"), F.lit(1)).try_cast("long").alias("lo"), F.split_part(F.concat_ws("-", "_s", "_s"), F.lit("-"), F.lit(2)).try_cast("long").alias("hi")).drop("_s")


def packed(rows: DataFrame, key: str, number: str) -> DataFrame:
    """Integers as spans of neighbours (gaps and islands)."""
    own = rows.select(key, number).distinct()
    island = F.col(number) - F.row_number().over(Window.partitionBy(key).orderBy(number))
    return own.withColumn("_i", island).groupBy(key, "_i").agg(F.min(number).alias("lo"), F.max(number).alias("hi")).drop("_i")


def hidden(observations: DataFrame, hidden_spans: DataFrame) -> DataFrame:
    """Observations read from hidden rows, by sheet."""
    inside = observations.join(F.broadcast(hidden_spans.withColumnRenamed("source_sheet", "_sheet")), (F.col("_sheet") == F.col("source_sheet")) & F.col("source_row").between(F.col("lo"), F.col("hi")), "left_semi")
    return inside.groupBy("source_sheet").agg(F.count("*").alias("hidden_observations"), F.countDistinct("source_row").alias("hidden_rows"))


def behaviour_drift(before: DataFrame, after: DataFrame, states: tuple[str, ...] = ("formula_cells", "hidden_rows", "hidden_columns")) -> DataFrame:
    """(source_sheet, state, before, after) where a sheet's behaviour changed between two vintages while its content did not.

    Either vintage has (source_sheet, content, and a count for each state); content is a hash of the values, as version_ids gives it. A
    sheet of one vintage only, or whose values changed, has no drift.
    """
    old = before.select("source_sheet", "content", *(F.col(c).alias(f"_{c}") for c in states))
    each = F.explode(F.array(*(F.struct(F.lit(c).alias("state"), F.col(f"_{c}").cast("long").alias("before"), F.col(c).cast("long").alias("after")) for c in states))).alias("e")
    return after.join(old, ["source_sheet", "content"]).select("source_sheet", each).select("source_sheet", "e.*").filter("not (before <=> after)")


def missing(grid: DataFrame, observations: DataFrame, cells: DataFrame) -> DataFrame:
    """Why an expected period has no observation, from the cell that should hold it."""
    absent = grid.join(observations.select("series_id", "period").distinct(), ["series_id", "period"], "left_anti")
    where = observations.groupBy("series_id").agg(F.min("source_sheet").alias("source_sheet"), F.min("source_column").alias("column_id"))
    axis = cells.select("source_sheet", "period", "row_id").distinct()
    located = absent.join(where, "series_id").join(axis, ["source_sheet", "period"], "left").join(cells.select("source_sheet", "row_id", "column_id", "tok", "num"), ["source_sheet", "row_id", "column_id"], "left")
    reason = (
        F.when(F.col("row_id").isNull(), "period_not_in_sheet").when(F.col("num").isNotNull(), "unread_cell")
        .when(F.col("tok") == "s/m", "not_meaningful").when(F.col("tok") == "", "blank_cell").otherwise("absent_cell")
    )
    return located.select("series_id", "period", reason.alias("reason"))


def rejections(rows: DataFrame) -> DataFrame:
    """Each row with the first test that it fails, or none."""
    day = F.try_to_date("fecha", "dd/MM/yyyy")
    reason = (
        F.when(T.blank(F.col("fecha")) | day.isNull(), "invalid_date")
        .when(T.malformed_number(F.col("volumen")), "invalid_numeric_token")
        .when(T.blank(F.col("instrumento")) | T.blank(F.col("moneda")), "missing_mandatory_dimension")
    )
    amount = F.replace(F.replace(F.trim("volumen"), F.lit("."), F.lit("")), F.lit(","), F.lit(".")).try_cast("decimal(18,2)")
    return rows.withColumn("reason", reason).withColumn("dia", day).withColumn("vol", amount)


def typed_trades(judged: DataFrame) -> DataFrame:
    """Accepted rows with a deterministic id, the ordinal among equal rows, and the status of a blank volume."""
    basis = F.sha2(F.concat_ws("|", F.date_format("dia", "yyyy-MM-dd"), F.coalesce(F.col("vol").cast("string"), F.lit("")), "instrumento", "moneda"), 256)
    # Rows of one basis are those of its four columns: they are numbered by these, and the hash is worked out afterwards.
    good = judged.filter("reason is null")
    nth = F.row_number().over(Window.partitionBy("dia", "vol", "instrumento", "moneda").orderBy("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"))
    return good.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "dia", "vol", "instrumento", "moneda", basis.alias("basis"), nth.cast("long").alias("ordinal"), F.when(F.col("vol").isNull(), "not_reported").otherwise("reported").alias("volume_status"))


def daily_activity(trades: DataFrame) -> DataFrame:
    """Rows with and without a volume, and its sum, by day and dimension."""
    return trades.groupBy("dia", "instrumento", "moneda").agg(F.count("*").alias("n_trades"), F.count("vol").alias("n_with_volume"), F.sum("vol").cast("double").alias("volume"))


def row_reconciliation(judged: DataFrame) -> DataFrame:
    """offered = accepted + rejected, by reason."""
    return judged.groupBy(F.coalesce("reason", F.lit("accepted")).alias("outcome")).agg(F.count("*").alias("n_rows"), F.count("vol").alias("n_with_volume"))


def blocked_families(sheets: DataFrame, *blocking: DataFrame) -> DataFrame:
    """Validated sheets that may not be promoted, with the reasons; each blocking part has (source_sheet, reason)."""
    reasons = reduce(DataFrame.unionByName, (b.select("source_sheet", "reason") for b in blocking)).distinct()
    held = sheets.filter("status = 'validated'").join(reasons, "source_sheet")
    return held.groupBy("source_sheet").agg(F.array_join(F.array_sort(F.collect_set("reason")), ";").alias("reasons"))


def token_problems(cells: DataFrame, register: DataFrame) -> DataFrame:
    """Tokens in use that the register explains neither for their sheet nor for all sheets."""
    used = cells.filter("tok is not null").groupBy("source_sheet", "tok").agg(F.count("*").alias("n_cells"))
    exact = register.filter("source_sheet <> '*'").select("source_sheet", "tok")
    every = register.filter("source_sheet = '*'").select("tok")
    return used.join(exact, ["source_sheet", "tok"], "left_anti").join(every, "tok", "left_anti").select("source_sheet", "tok", "n_cells")


def review_queue(sheets: DataFrame) -> DataFrame:
    """sheets (source_sheet, n_cells, n_outside, n_numbers_outside) with open numbers first, then those with open cells."""
    tier = F.when(F.col("n_numbers_outside") * 2 > F.col("n_outside"), 1).when(F.col("n_outside") > 0, 2).otherwise(3)
    return sheets.select("source_sheet", tier.alias("tier"), (F.col("n_numbers_outside") * (4 - tier)).alias("weight"))
