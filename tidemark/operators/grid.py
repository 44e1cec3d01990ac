"""Worksheet layouts as one job over the long cell table (source_sheet, row_id, column_id, text, num, date).

Axes are found by counting, layouts by comparing counts, and every layout's extractor runs over all its sheets at once:
fill the axis, join it to the value cells, project (series, period, value, coordinates).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import periods as P
from ..functions import text as T
from ..sources.stored import saved
from .dated import vertical_dates

OUT = ("source_sheet", "series", "period", "value", "row_id", "column_id")


def year_axes(cells: DataFrame, line: str, across: str, least: int = 3, widest_gap: int = 10) -> DataFrame:
    """Lines (rows or columns) whose years rise by at most ``widest_gap`` from cell to cell, with their number."""
    years = cells.select("source_sheet", line, across, T.year_label(F.col("text")).alias("y")).filter("y is not null")
    step = F.col("y") - F.lag("y").over(Window.partitionBy("source_sheet", line).orderBy(across))
    judged = years.withColumn("step", step).groupBy("source_sheet", line).agg(F.count("*").alias("n"), F.bool_and(F.col("step").isNull() | F.col("step").between(1, widest_gap)).alias("coherent"))
    return judged.filter(F.col("coherent") & (F.col("n") >= least)).select("source_sheet", line, "n")


def consecutive_years(cells: DataFrame) -> DataFrame:
    """Header rows of years without gaps."""
    return year_axes(cells, "row_id", "column_id", widest_gap=1)


def _densest(cells: DataFrame, line: str, flag, name: str) -> DataFrame:
    counted = cells.filter(flag).groupBy("source_sheet", line).agg(F.count("*").alias("n"))
    return counted.groupBy("source_sheet").agg(F.max("n").alias(name))


def layouts(cells: DataFrame) -> DataFrame:
    """The orientation of each sheet from how many dates, years, months and quarters its fullest lines hold."""
    is_date, month, quarter = F.col("date").isNotNull(), T.month_number(F.col("text")).isNotNull(), T.quarter_number(F.col("text")).isNotNull()
    parts = [
        _densest(cells, "row_id", is_date, "date_row"), _densest(cells, "column_id", is_date, "date_col"),
        year_axes(cells, "row_id", "column_id", 1).groupBy("source_sheet").agg(F.max("n").alias("year_row")),
        year_axes(cells, "column_id", "row_id", 1).groupBy("source_sheet").agg(F.max("n").alias("year_col")),
        _densest(cells, "column_id", month, "month_col"), _densest(cells, "row_id", quarter, "quarter_row"), _densest(cells, "column_id", quarter, "quarter_col"),
    ]
    counts = reduce(lambda a, b: a.join(b, "source_sheet", "left"), parts, cells.select("source_sheet").distinct()).na.fill(0)
    at = lambda c: F.col(c) >= 3
    mode = (
        F.when(at("date_col") & (F.col("date_col") >= F.col("date_row")), "vertical_date").when(at("date_row"), "horizontal_date")
        .when(at("year_row") & at("quarter_row"), "horizontal_year_quarter").when(at("year_row") & at("month_col"), "horizontal_year_month").when(at("year_row"), "horizontal_year")
        .when(at("year_col") & (at("month_col") | at("quarter_col")), "vertical_block").when(at("year_col"), "vertical_year").otherwise("unparsed")
    )
    return counts.select("source_sheet", mode.alias("mode"))


def _fullest_row(axes: DataFrame) -> DataFrame:
    return axes.groupBy("source_sheet").agg(F.max_by("row_id", F.struct("n", -F.col("row_id"))).alias("header_row"))


def _labels(cells: DataFrame) -> DataFrame:
    """The leftmost text of each row."""
    return cells.filter(~T.blank(F.col("text"))).groupBy("source_sheet", "row_id").agg(F.min_by("text", "column_id").alias("label"))


def _year_header(cells: DataFrame) -> DataFrame:
    header = _fullest_row(year_axes(cells, "row_id", "column_id"))
    years = cells.select("source_sheet", "row_id", "column_id", T.year_label(F.col("text")).alias("y")).filter("y is not null")
    return years.join(header, (years["source_sheet"] == header["source_sheet"]) & (years["row_id"] == F.col("header_row"))).select(years["source_sheet"], "column_id", "y", "header_row")


def horizontal_year(cells: DataFrame) -> DataFrame:
    """Years across, labels down."""
    values = cells.filter("num is not null").select("source_sheet", "row_id", "column_id", "num")
    joined = values.join(_year_header(cells), ["source_sheet", "column_id"]).filter("row_id > header_row").join(_labels(cells), ["source_sheet", "row_id"])
    return joined.select("source_sheet", F.col("label").alias("series"), F.make_date("y", F.lit(12), F.lit(31)).alias("period"), F.col("num").alias("value"), "row_id", "column_id")


def horizontal_year_month(cells: DataFrame) -> DataFrame:
    """Years across, months down."""
    rows = horizontal_year(cells).withColumn("m", T.month_number(F.col("series"))).filter("m is not null")
    return rows.withColumn("period", P.month_end(F.year("period"), F.col("m"))).withColumn("series", F.col("source_sheet")).select(*OUT)


def quarter_axis(cells: DataFrame) -> DataFrame:
    """(sheet, column_id, label, year, quarter, inferred, annual_year, annual, header_row, period_row).

    A year stands above the first column of a block, quarters and the annual column that closes it stand in the fullest
    row of quarters below. A block runs to its annual column (a year, or total or anual), else at most three columns on. A label that names
    no quarter gets one from its place only within a block of four and an annual column whose other labels agree with theirs.
    """
    header = _fullest_row(year_axes(cells, "row_id", "column_id"))
    quarter = cells.select("source_sheet", "row_id", T.quarter_number(F.col("text")).alias("q")).filter("q is not null").join(header, "source_sheet").filter("row_id > header_row")
    counted = quarter.groupBy("source_sheet", "header_row", "row_id").agg(F.count("*").alias("n"))
    rows = counted.groupBy("source_sheet", "header_row").agg(F.max_by("row_id", F.struct("n", -F.col("row_id"))).alias("period_row"))
    held = cells.join(rows, "source_sheet")
    label = F.max(F.when(F.col("row_id") == F.col("period_row"), F.col("text")))
    year = F.max(F.when(F.col("row_id") == F.col("header_row"), T.year_label(F.col("text"))))
    columns = held.filter("row_id >= header_row").groupBy("source_sheet", "column_id", "header_row", "period_row").agg(label.alias("label"), year.alias("y"))
    along = Window.partitionBy("source_sheet").orderBy("column_id").rowsBetween(Window.unboundedPreceding, 0)
    start = F.last(F.when(F.col("y").isNotNull(), F.col("column_id")), ignorenulls=True).over(along)
    columns = columns.withColumn("start", start).withColumn("year", F.last("y", ignorenulls=True).over(along)).filter("start is not null")
    named = T.quarter_number(F.col("label"))
    closes = F.coalesce(T.normalized(F.col("label")).rlike("total|anual|ano") | T.year_label(F.col("label")).isNotNull(), F.lit(False))
    block, slot = Window.partitionBy("source_sheet", "start"), Window.partitionBy("source_sheet", "start").orderBy("column_id")
    columns = columns.withColumn("named", named).withColumn("annual_at", F.min(F.when(closes, F.col("column_id"))).over(block)).withColumn("slot", F.row_number().over(slot))
    before = F.col("column_id") < F.col("annual_at")
    whole = (F.count_if(before).over(block) == 4) & F.bool_and(~before | F.col("named").isNull() | (F.col("named") == F.col("slot"))).over(block)
    guess = F.when(whole & before & F.col("named").isNull(), F.col("slot"))
    end = F.coalesce("annual_at", F.col("start") + 3)
    return columns.filter(F.col("column_id") <= end).select(
        "source_sheet", "column_id", "label", "year", F.coalesce("named", guess).alias("quarter"), guess.isNotNull().alias("inferred"), T.year_label(F.col("label")).alias("annual_year"),
        (F.col("column_id") == F.coalesce("annual_at", F.lit(-1))).alias("annual"), "header_row", "period_row",
    )


def quarter_closing(cells: DataFrame, axis: DataFrame, least: float = 0.9) -> DataFrame:
    """(sheet, annual_columns, compared, agreed, reason) for each sheet with annual columns by year.

    In a table of stocks the fourth quarter is the year's end: it must equal the annual column that closes its block, where
    that is of the same year. reason is null where it does in ``least`` of the comparable cells, else what shows that years are misread.
    """
    fourth = F.last(F.when(F.col("quarter") == 4, F.struct("column_id", "year")), ignorenulls=True).over(Window.partitionBy("source_sheet").orderBy("column_id").rowsBetween(Window.unboundedPreceding, -1))
    closed = axis.withColumn("fourth", fourth).filter("annual and annual_year is not null and fourth is not null")
    closed = closed.select("source_sheet", "period_row", F.col("column_id").alias("annual_column"), F.col("fourth.column_id").alias("fourth_column"), (F.col("fourth.year") == F.col("annual_year")).alias("same"))
    values = lambda c, v: cells.filter("num is not null").select("source_sheet", "row_id", F.col("column_id").alias(c), F.col("num").alias(v))
    pairs = closed.filter("same").join(values("annual_column", "a"), ["source_sheet", "annual_column"]).filter("row_id > period_row").join(values("fourth_column", "b"), ["source_sheet", "row_id", "fourth_column"])
    agrees = F.abs(F.col("a") - F.col("b")) <= 1e-6 * F.greatest(F.abs("a"), F.lit(1.0))
    found = pairs.groupBy("source_sheet").agg(F.count("*").alias("compared"), F.count_if(agrees).alias("agreed"))
    whole = closed.groupBy("source_sheet").agg(F.count("*").alias("annual_columns"), F.count_if("same").alias("same")).join(found, "source_sheet", "left").na.fill(0)
    reason = F.when(F.col("same") == 0, "no block is of its annual column's year").when(F.col("agreed") < least * F.col("compared"), "fourth quarters differ from the years that they close")
    return whole.select("source_sheet", "annual_columns", "compared", "agreed", reason.alias("reason"))


def horizontal_year_quarter(cells: DataFrame, least: float = 0.9) -> DataFrame:
    """Quarters, and annual columns as series of their own, of the sheets whose blocks close; see quarter_closing for the others."""
    axis = quarter_axis(cells)
    refused = quarter_closing(cells, axis, least).filter("reason is not null")
    read = axis.filter("quarter is not null or annual").join(refused, "source_sheet", "left_anti")
    values = cells.filter("num is not null").select("source_sheet", "row_id", "column_id", "num")
    joined = values.join(read.drop("label"), ["source_sheet", "column_id"]).filter("row_id > period_row").join(_labels(cells), ["source_sheet", "row_id"])
    period = F.when(F.col("annual"), F.make_date(F.coalesce("annual_year", "year"), F.lit(12), F.lit(31))).otherwise(P.quarter_end(F.col("year"), F.col("quarter")))
    series = T.path(F.col("label"), F.when(F.col("annual"), "anual"))
    return joined.select("source_sheet", series.alias("series"), period.alias("period"), F.col("num").alias("value"), "row_id", "column_id")


def vertical_date(cells: DataFrame) -> DataFrame:
    """Dates down, without merged ranges."""
    return vertical_dates(cells).select(*OUT)


def horizontal_date(cells: DataFrame) -> DataFrame:
    """Dates across the fullest date row, labels down."""
    days = cells.filter("date is not null").select("source_sheet", "row_id", "column_id", F.last_day("date").alias("period"))
    header = _fullest_row(days.groupBy("source_sheet", "row_id").agg(F.count("*").alias("n")))
    axis = days.join(header, "source_sheet").filter("row_id = header_row").select("source_sheet", "column_id", "period", "header_row")
    values = cells.filter("num is not null").select("source_sheet", "row_id", "column_id", F.col("num").alias("value"))
    return values.join(axis, ["source_sheet", "column_id"]).filter("row_id > header_row").join(_labels(cells).withColumnRenamed("label", "series"), ["source_sheet", "row_id"]).select(*OUT)


def _vertical(cells: DataFrame) -> DataFrame:
    """Rows of a sheet under the years of its fullest year column, with the texts above the first year as headers."""
    axes = year_axes(cells, "column_id", "row_id", widest_gap=10)
    axis = axes.groupBy("source_sheet").agg(F.max_by("column_id", F.struct("n", -F.col("column_id"))).alias("axis"))
    years = cells.select("source_sheet", "row_id", "column_id", T.year_label(F.col("text")).alias("y")).filter("y is not null").join(axis, "source_sheet").filter("column_id = axis")
    first = years.groupBy("source_sheet").agg(F.min("row_id").alias("first_row"), F.max("axis").alias("axis"))
    header = cells.filter(~T.blank(F.col("text"))).join(first, "source_sheet").filter("row_id < first_row").groupBy("source_sheet", "column_id").agg(F.max_by("text", "row_id").alias("series"))
    marked = cells.select("source_sheet", "row_id").distinct().join(years.select("source_sheet", "row_id", "y"), ["source_sheet", "row_id"], "left")
    down = Window.partitionBy("source_sheet").orderBy("row_id").rowsBetween(Window.unboundedPreceding, 0)
    rows = marked.select("source_sheet", "row_id", F.col("y").alias("own"), F.last("y", ignorenulls=True).over(down).alias("y")).filter("y is not null")
    values = cells.filter("num is not null").select("source_sheet", "row_id", "column_id", F.col("num").alias("value"))
    return values.join(rows, ["source_sheet", "row_id"]).join(first.select("source_sheet", "axis"), "source_sheet").filter("column_id <> axis").join(header, ["source_sheet", "column_id"])


def vertical_year(cells: DataFrame) -> DataFrame:
    """Years down one column, headers above them."""
    return _vertical(cells).filter("own is not null").withColumn("period", F.make_date("own", F.lit(12), F.lit(31))).select(*OUT)


def vertical_block(cells: DataFrame) -> DataFrame:
    """Years down one column, each above or beside its months or quarters; a year's own row without either is annual."""
    words = cells.select("source_sheet", "row_id", T.month_number(F.col("text")).alias("m"), T.quarter_number(F.col("text")).alias("q")).groupBy("source_sheet", "row_id").agg(F.max("m").alias("m"), F.max("q").alias("q"))
    rows = _vertical(cells).join(words, ["source_sheet", "row_id"])
    month = F.coalesce("m", F.col("q") * 3, F.when(F.col("own").isNotNull(), 12))
    return rows.withColumn("period", P.month_end(F.col("y"), month)).filter("period is not null").select(*OUT)


EXTRACTORS = {
    "horizontal_year": horizontal_year, "horizontal_year_month": horizontal_year_month, "horizontal_year_quarter": horizontal_year_quarter, "vertical_date": vertical_date,
    "horizontal_date": horizontal_date, "vertical_year": vertical_year, "vertical_block": vertical_block}


def read_as(cells: DataFrame, mode: str) -> DataFrame:
    """The observations of the sheets, among all of them, that are of one layout."""
    own = saved(layouts(cells), "layouts").filter(F.col("mode") == mode).select("source_sheet")
    return EXTRACTORS[mode](cells.join(F.broadcast(own), "source_sheet", "left_semi")).select(*OUT)


def observations(cells: DataFrame, overrides: DataFrame | None = None) -> DataFrame:
    """Every sheet by its layout, a per-sheet override first; one plan for all sheets, no loop over them."""
    modes = saved(layouts(cells), "layouts")
    if overrides is not None:
        modes = modes.join(F.broadcast(overrides.select("source_sheet", F.col("mode").alias("_mode"))), "source_sheet", "left").select("source_sheet", F.coalesce("_mode", "mode").alias("mode"))
    placed = cells.join(modes, "source_sheet")
    return reduce(DataFrame.unionByName, (f(placed.filter(F.col("mode") == m).drop("mode")).select(*OUT) for m, f in EXTRACTORS.items()))


def titles(cells: DataFrame, data_from: int = 3) -> DataFrame:
    """The texts above the data, each once, in reading order."""
    above = cells.filter(~T.blank(F.col("text")) & (F.col("row_id") < data_from) & T.year_label(F.col("text")).isNull())
    listed = F.transform(F.sort_array(F.collect_list(F.struct("row_id", "column_id", "text"))), lambda x: x["text"])
    return above.groupBy("source_sheet").agg(F.array_join(F.array_distinct(listed), " — ").alias("title"))


def identified(rows: DataFrame) -> DataFrame:
    """A series' id from its sheet and path; where one path names several columns or rows in a period, a lane tells them apart."""
    lane = F.row_number().over(Window.partitionBy("source_sheet", "series", "period").orderBy("row_id", "column_id"))
    size = F.count("*").over(Window.partitionBy("source_sheet", "series", "period"))
    laned = rows.withColumn("lane", F.when(size > 1, lane).otherwise(F.lit(0)))
    return laned.withColumn("series_id", T.hashed_id("series:", F.col("source_sheet"), F.col("series"), F.col("lane").cast("string"))).withColumn("stability", F.when(F.col("lane") > 0, "positional").otherwise("stable"))


def _digest(rows: DataFrame, by: list[str], order: str) -> DataFrame:
    """One sha-256 for each group, of its members' ``e`` in order."""
    ordered = F.transform(F.sort_array(F.collect_list(F.struct(order, "e"))), lambda x: x["e"])
    return rows.groupBy(*by).agg(F.sha2(F.array_join(ordered, ";"), 256).alias("e"), F.sum("_n").alias("_n"))


def version_ids(cells: DataFrame) -> DataFrame:
    """A sheet's content as a hash over hashes of 1,024 rows each, over hashes of rows: no list holds a whole sheet."""
    entry = F.concat_ws("|", "row_id", "column_id", F.coalesce("text", F.lit("")), F.coalesce(F.col("num").cast("decimal(38,6)").cast("string"), F.lit("")), F.coalesce(F.date_format("date", "yyyy-MM-dd"), F.lit("")))
    each = cells.select("source_sheet", F.floor(F.col("row_id") / 1024).alias("_block"), "row_id", "column_id", entry.alias("e"), F.lit(1).alias("_n"))
    whole = _digest(_digest(_digest(each, ["source_sheet", "_block", "row_id"], "column_id"), ["source_sheet", "_block"], "row_id"), ["source_sheet"], "_block")
    return whole.select("source_sheet", F.substring("e", 1, 24).alias("sheet_version_id"), F.col("_n").alias("n_cells"))


def new_versions(versions: DataFrame, stored: DataFrame) -> DataFrame:
    """A10: versions that aren't stored yet, each once."""
    return versions.groupBy("sheet_version_id").agg(F.min("source_sheet").alias("source_sheet")).join(stored, "sheet_version_id", "left_anti")


def header_fingerprints(cells: DataFrame, rows: int = 12) -> DataFrame:
    """A hash of the text of the first text rows."""
    texts = cells.filter(~T.blank(F.col("text")) & F.col("num").isNull()).withColumn("k", F.dense_rank().over(Window.partitionBy("source_sheet").orderBy("row_id"))).filter(F.col("k") <= rows)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("row_id", "column_id", T.normalized(F.col("text")).alias("t")))), lambda x: x["t"])
    return texts.groupBy("source_sheet").agg(F.substring(F.sha2(F.array_join(ordered, "|"), 256), 1, 24).alias("fingerprint"))


def header_changes(before: DataFrame, after: DataFrame) -> DataFrame:
    """Sheets of the later vintage, and whether their header text differs from the vintage before; new sheets count as changed."""
    old = header_fingerprints(before).select("source_sheet", F.col("fingerprint").alias("_old"))
    return header_fingerprints(after).join(old, "source_sheet", "left").select("source_sheet", "fingerprint", (~F.col("fingerprint").eqNullSafe(F.col("_old"))).alias("changed"))


def report_coverage(cells: DataFrame) -> DataFrame:
    """A coverage row for each sheet of a report-style workbook, with the version that its cells are stored under."""
    held = cells.groupBy("source_sheet").agg(F.max("row_id").alias("last_row"), F.max("column_id").alias("last_column"), F.count("num").alias("n_numbers"), F.count("text").alias("n_texts"))
    return held.join(version_ids(cells), "source_sheet")
