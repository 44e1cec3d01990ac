"""Worksheets with dates down (H05): which columns are data is judged by density, by late starts, by headers and by merged headers.

Rows are of three kinds: dated ones, annual ones (a year in the axis column) and operations, rows without a date beneath a dated
one. Where most rows have no date, the sheet is one of blocks instead, and a date holds until the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import text as T
from ..sources.stored import saved

SHEET = "source_sheet"
#: Rows above the data that may be headers, and the share of the dated rows that a column needs to count as dense.
HEADER_ROWS, DENSE = 8, 0.05


def _ordered(by: list[str], order: str):
    return Window.partitionBy(*by).orderBy(order)


def date_axis(cells: DataFrame) -> DataFrame:
    """(sheet, axis, monthly): the fullest date column of each sheet, the first of equals; monthly where its dates lie a month or more apart."""
    dates = cells.filter("date is not null")
    counted = dates.groupBy(SHEET, "column_id").agg(F.count("*").alias("n"), F.date_diff(F.max("date"), F.min("date")).alias("days"))
    best = counted.groupBy(SHEET).agg(F.max_by(F.struct("column_id", "n", "days"), F.struct("n", -F.col("column_id"))).alias("b"))
    return best.select(SHEET, F.col("b.column_id").alias("axis"), (F.col("b.days") >= 27 * (F.col("b.n") - 1)).alias("monthly"))


def dated_rows(cells: DataFrame) -> DataFrame:
    """(sheet, row_id, axis, kind, date, nth): rows with numbers beside the axis, from the first date on.

    kind is dated, block (date of the last dated row, where more rows lack a date than half of those that have one), annual
    (date: the end of its year) or operation (date of the dated row above, nth of those beneath it).
    """
    axis = date_axis(cells)
    at = cells.join(F.broadcast(axis), SHEET)
    rows = at.groupBy(SHEET, "row_id", "axis", "monthly").agg(
        F.max(F.when(F.col("column_id") == F.col("axis"), F.col("date"))).alias("own"),
        F.max(F.when(F.col("column_id") == F.col("axis"), T.year_label(F.col("text")))).alias("year"),
        F.bool_or((F.col("column_id") > F.col("axis")) & F.col("num").isNotNull()).alias("numbers"),
    )
    rows = rows.withColumn("own", F.when(F.col("monthly"), F.last_day("own")).otherwise(F.col("own")))
    whole, down = Window.partitionBy(SHEET), _ordered([SHEET], "row_id")
    has = F.col("own").isNotNull()
    rows = rows.withColumn("first", F.min(F.when(has, F.col("row_id"))).over(whole)).withColumn("last", F.max(F.when(has, F.col("row_id"))).over(whole)).filter("row_id >= first")
    lacking = F.count_if(F.col("numbers") & ~has & (F.col("row_id") <= F.col("last"))).over(whole)
    rows = rows.withColumn("block", lacking > F.greatest(F.lit(3), F.count_if(has).over(whole) / 2)).withColumn("above", F.last("own", ignorenulls=True).over(down.rowsBetween(Window.unboundedPreceding, 0)))
    kind = F.when(F.col("block"), "block").when(has, "dated").when(F.col("year").isNotNull(), "annual").when(F.col("row_id") <= F.col("last"), "operation")
    rows = rows.filter("numbers").withColumn("kind", kind).filter("kind is not null")
    date = F.when(F.col("kind") == "annual", F.make_date("year", F.lit(12), F.lit(31))).otherwise(F.col("above"))
    # The place of an operation under its dated row.
    group = F.sum(has.cast("int")).over(down)
    rows = rows.withColumn("g", group).withColumn("nth", F.when(F.col("kind") == "operation", F.sum((F.col("kind") == "operation").cast("int")).over(_ordered([SHEET, "g"], "row_id"))))
    return rows.select(SHEET, "row_id", "axis", "kind", date.alias("date"), "nth")


def data_columns(cells: DataFrame, rows: DataFrame, merges: DataFrame | None = None) -> DataFrame:
    """(sheet, column_id, why): columns right of the axis that hold data, and what shows it.

    dense: numbers in at least 2 and a twentieth of the dated rows; late: 2 or more numbers without a gap to the last row, under
    any text; headed: a text of its own on the header rows; merged: a merged header that it shares with one of the others. Columns
    that mostly hold dates are none.
    """
    main = rows.filter("kind in ('dated', 'block')").withColumn("k", F.row_number().over(_ordered([SHEET], "row_id")))
    sheet = main.groupBy(SHEET).agg(F.count("*").alias("n"), F.min("row_id").alias("data_from"), F.max("axis").alias("axis"))
    inside = cells.join(main.select(SHEET, "row_id", "k"), [SHEET, "row_id"])
    stats = inside.groupBy(SHEET, "column_id").agg(F.count("num").alias("numbers"), F.count("date").alias("dates"), F.min(F.when(F.col("num").isNotNull(), F.col("k"))).alias("since"))
    texts = cells.filter(~T.blank(F.col("text"))).join(F.broadcast(sheet.select(SHEET, "data_from", "axis")), SHEET).filter("row_id < data_from")
    above = texts.groupBy(SHEET, "column_id").agg(F.count("*").alias("texts"))
    judged = stats.join(F.broadcast(sheet), SHEET).filter("column_id > axis and numbers > 0").join(above, [SHEET, "column_id"], "left")
    floor = F.greatest(F.lit(2), F.floor(F.col("n") * DENSE))
    dense, late = F.col("numbers") >= floor, (F.col("numbers") >= 2) & (F.col("numbers") == F.col("n") - F.col("since") + 1) & (F.coalesce("texts", F.lit(0)) > 0)
    judged = judged.filter(F.col("dates") < floor).select(SHEET, "column_id", F.when(dense, "dense").when(late, "late").alias("why"))
    sure = judged.filter("why is not null")
    heads = header_rows(texts, sure)
    own = texts.join(F.broadcast(heads), [SHEET, "row_id"]).select(SHEET, "column_id").distinct().withColumn("own", F.lit(True))
    accepted = judged.join(own, [SHEET, "column_id"], "left").select(SHEET, "column_id", F.coalesce("why", F.when(F.col("own"), "headed")).alias("why"))
    if merges is None:
        return accepted.filter("why is not null")
    top = heads.groupBy(SHEET).agg(F.min("row_id").alias("top"))
    spans = merges.join(F.broadcast(top), SHEET).filter("top between row_from and row_to")
    titled = texts.select(SHEET, F.col("row_id").alias("top"), F.col("column_id").alias("column_from"))
    spans = spans.join(titled, [SHEET, "top", "column_from"], "left_semi").select(SHEET, F.explode(F.sequence("column_from", "column_to")).alias("column_id"), F.col("column_from").alias("span"))
    spanned = accepted.join(spans, [SHEET, "column_id"], "left")
    beside = F.count("why").over(Window.partitionBy(SHEET, "span")) > 0
    return spanned.withColumn("why", F.coalesce("why", F.when(F.col("span").isNotNull() & beside, "merged"))).filter("why is not null").select(SHEET, "column_id", "why").distinct()


def header_rows(texts: DataFrame, columns: DataFrame) -> DataFrame:
    """(sheet, row_id) of the last rows above the data with texts over two or more of the columns (one, where there is only one), else the last with any."""
    n = columns.groupBy(SHEET).agg(F.count("*").alias("n_columns"))
    near = texts.filter(F.col("row_id") >= F.col("data_from") - HEADER_ROWS).join(columns.select(SHEET, "column_id"), [SHEET, "column_id"], "left_semi")
    filled = near.groupBy(SHEET, "row_id").agg(F.count("*").alias("texts")).join(n, SHEET)
    judged = filled.withColumn("enough", F.col("texts") >= F.least(F.lit(2), F.col("n_columns")))
    whole = Window.partitionBy(SHEET)
    judged = judged.withColumn("any", F.bool_or("enough").over(whole)).withColumn("last", F.max("row_id").over(whole))
    return judged.filter("enough or (not any and row_id = last)").select(SHEET, "row_id")


def column_labels(cells: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """(sheet, column_id, label): the header rows' texts, each once.

    A header holds to the right until the next one. In a column that only its headers or a merged one brought in this is so for
    the top row alone: below it a blank says nothing. A column without any is called by its number.
    """
    data_from = rows.filter("kind in ('dated', 'block')").groupBy(SHEET).agg(F.min("row_id").alias("data_from"), F.max("axis").alias("axis"))
    texts = cells.filter(~T.blank(F.col("text"))).join(F.broadcast(data_from), SHEET).filter("row_id < data_from")
    heads = header_rows(texts, columns.filter("why in ('dense', 'late')"))
    places = columns.join(F.broadcast(heads), SHEET).select(SHEET, "row_id", "column_id", "why")
    own = texts.join(F.broadcast(heads), [SHEET, "row_id"]).select(SHEET, "row_id", "column_id", F.trim("text").alias("text"))
    both = places.join(own, [SHEET, "row_id", "column_id"], "full_outer")
    filled = F.last("text", ignorenulls=True).over(_ordered([SHEET, "row_id"], "column_id").rowsBetween(Window.unboundedPreceding, 0))
    top = F.col("row_id") == F.min("row_id").over(Window.partitionBy(SHEET))
    shown = both.withColumn("shown", F.when(F.col("why").isin("headed", "merged") & ~top, F.col("text")).otherwise(filled)).filter("why is not null")
    listed = F.transform(F.sort_array(F.collect_list(F.when(F.col("shown").isNotNull(), F.struct("row_id", "shown")))), lambda x: x["shown"])
    found = shown.groupBy(SHEET, "column_id").agg(F.array_join(F.array_distinct(listed), " — ").alias("label"))
    named = columns.select(SHEET, "column_id").join(found, [SHEET, "column_id"], "left")
    return named.select(SHEET, "column_id", F.coalesce(F.nullif("label", F.lit("")), F.concat(F.lit("column_"), F.col("column_id").cast("string"))).alias("label"))


def row_labels(cells: DataFrame, rows: DataFrame, columns: DataFrame) -> DataFrame:
    """(sheet, row_id, row_label): the texts between the axis and the first data column, each holding down until the next."""
    first = columns.groupBy(SHEET).agg(F.min("column_id").alias("first_column"))
    texts = cells.filter(~T.blank(F.col("text"))).join(F.broadcast(first), SHEET).filter("column_id < first_column").select(SHEET, "row_id", "column_id", F.trim("text").alias("text"))
    main = rows.filter("kind in ('dated', 'block')").select(SHEET, "row_id", "axis")
    inside = texts.join(main, [SHEET, "row_id"]).filter("column_id > axis")
    lanes = inside.select(SHEET, "column_id").distinct()
    placed = main.join(lanes, SHEET).join(inside.select(SHEET, "row_id", "column_id", "text"), [SHEET, "row_id", "column_id"], "left")
    held = placed.withColumn("held", F.last("text", ignorenulls=True).over(_ordered([SHEET, "column_id"], "row_id").rowsBetween(Window.unboundedPreceding, 0)))
    listed = F.transform(F.sort_array(F.collect_list(F.when(F.col("held").isNotNull(), F.struct("column_id", "held")))), lambda x: x["held"])
    return held.groupBy(SHEET, "row_id").agg(F.array_join(F.array_distinct(listed), " — ").alias("row_label"))


def vertical_dates(cells: DataFrame, merges: DataFrame | None = None) -> DataFrame:
    """(sheet, series, period, value, row_id, column_id, kind) of every sheet with dates down; merges are the merged header
    ranges (sheet, row_from, row_to, column_from, column_to). A sheet without a date column gives no rows."""
    rows = saved(dated_rows(cells), "dated-rows")  # both are used again and again below: one plan of all would be planned for minutes
    columns = saved(data_columns(cells, rows, merges), "data-columns")
    values = cells.filter("num is not null").select(SHEET, "row_id", "column_id", F.col("num").alias("value"))
    joined = values.join(rows.select(SHEET, "row_id", "kind", F.col("date").alias("period"), "nth"), [SHEET, "row_id"]).join(column_labels(cells, rows, columns), [SHEET, "column_id"])
    joined = joined.join(row_labels(cells, rows, columns), [SHEET, "row_id"], "left").filter("period is not null")
    operation = F.when(F.col("kind") == "operation", F.concat(F.lit("operacion "), F.col("nth").cast("string")))
    own = F.when(F.col("kind").isin("dated", "block"), F.col("row_label"))
    return joined.select(SHEET, T.path(own, F.col("label"), operation).alias("series"), "period", "value", "row_id", "column_id", "kind")
